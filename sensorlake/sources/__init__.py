"""Sources and sinks: landing-table readers, partition refresh, mart export,
and the mappings from the shared test tables onto the raw landing shapes."""
