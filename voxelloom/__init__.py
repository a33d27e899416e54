"""A PySpark engine for tiled image volumes, neuron tracings and large document tables."""
