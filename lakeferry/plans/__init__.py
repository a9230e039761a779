"""The three lifecycles as one plan each: permissions, inventory and sync, grants."""
