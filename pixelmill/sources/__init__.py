"""Image listing, header and pixel decoding, JSON lines."""
