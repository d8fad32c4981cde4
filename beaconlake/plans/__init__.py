"""Jobs that create, fill, check and expire tables."""
