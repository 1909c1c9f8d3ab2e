"""The registered query catalogue (Spark side) and its SQL oracle."""
