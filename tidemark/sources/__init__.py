"""Where rows come from and go to: the schema catalog, the partitioned lake, the relational source."""
