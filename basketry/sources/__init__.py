"""Where rows come from: delimited files, stored tables and the test fixtures."""
