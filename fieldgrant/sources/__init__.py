"""Reading landed files and writing bronze and silver tables."""
