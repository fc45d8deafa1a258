"""Column functions over whole listings and manifests."""
