"""Model catalog (DAG), query registry, sinks and audit bindings."""
