"""Raw table loaders and the fixture views over the driver's test data."""
