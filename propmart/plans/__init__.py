"""Jobs (formatted, exploitation, model, landing) and the analog query set."""
