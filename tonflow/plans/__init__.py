"""Business tables: from raw source rows through conformed tables to daily marts."""
