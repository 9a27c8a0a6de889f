"""Where rows come from and go to: declared schemas, readers, sinks, constant rows."""
