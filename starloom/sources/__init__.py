"""Where rows come from and go to: contracts, files, JDBC, layers, loads."""
