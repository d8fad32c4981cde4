"""DataFrame-to-DataFrame operators over the warehouse tables."""
