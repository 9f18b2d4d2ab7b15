"""Where rows come from: landed files, relational tables, the change feed."""
