"""Tables, layouts, schemas and the model registry."""
