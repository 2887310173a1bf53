"""Where data comes from: landing area, hit files, lookup bundles, schemas."""
