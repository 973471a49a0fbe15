"""Stream specifications and the layer runs built from them."""
