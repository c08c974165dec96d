"""Adapters around external tools, imported only where they are used. All can be replaced by functions of the same shape."""
