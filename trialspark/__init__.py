"""Clinical-trial analytics as Spark jobs: pure ``DataFrame -> DataFrame`` functions."""
