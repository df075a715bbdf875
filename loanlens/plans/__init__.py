"""Domain plans (the reference's feature, training and profiling jobs) and
the registry of checked queries over the driver tables."""
