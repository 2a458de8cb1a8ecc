"""Reading and writing: dated raw landings, layer tables, and views over the sample star schema."""
