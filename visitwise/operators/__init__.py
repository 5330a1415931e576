"""Multi-row operators: joins, ranks, buckets, calendar, grouping, EAV."""
