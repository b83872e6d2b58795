"""Reports over the warehouse tables and the registered query catalog."""
