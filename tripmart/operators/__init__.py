"""DataFrame -> DataFrame operators: silver, dimensions, fact, marts, quality, profiling."""
