"""Models, training, prediction and serving queries built from the operators."""
