"""Part of corpuskiln."""
