"""Reading registers and tables, writing tables and exports."""
