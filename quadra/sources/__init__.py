"""Landing scans, the partitioned lake and the adapter over the driver tables."""
