"""Array kernels on one page image: unsigned bytes, height x width x (blue, green, red)."""
