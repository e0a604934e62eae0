"""Reading and writing the tables and models."""
