"""Whole jobs: cleaning the warehouse tables, landing the marketplace files, answering the questions."""
