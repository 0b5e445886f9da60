"""Reading exports, contracts and warehouse tables; writing warehouse, report and work tables."""
