"""Independent SQL for comparing results in a second engine."""
