"""Training-data operators over a ``documents`` table; nothing outside this subpackage imports it."""
