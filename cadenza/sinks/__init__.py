"""Writers beside the day-partitioned tables."""
