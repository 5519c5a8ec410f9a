"""Raw files, seeds, date shards, stored tables and the bindings of generic tables to roles."""
