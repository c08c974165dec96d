"""Sources: listings with file heads, contents, manifests and recognized documents."""
