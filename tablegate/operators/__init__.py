"""DataFrame -> DataFrame operators: gate, enrich, audit, reconcile, report."""
