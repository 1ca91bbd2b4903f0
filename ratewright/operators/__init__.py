"""DataFrame operators: flattening, joins, selection, registry, shards, audit."""
