"""Named pipelines as lazy ``DataFrame -> DataFrame`` functions."""
