"""Raw file readers and the layered table store."""
