"""Analytics over mobile-device location readings, written for Spark."""
