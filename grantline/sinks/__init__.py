"""Tables, documents and counts."""
