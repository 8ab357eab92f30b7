"""Where rows, changes and positions come from and go to."""
