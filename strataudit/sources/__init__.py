"""Reading and writing layer tables and run history."""
