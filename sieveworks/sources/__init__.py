"""Sources: landed files of each kind, and live readers that stay off unless asked for."""
