"""Writers; every one of them may be repeated for the same batch without doubling rows."""
