"""DataFrame-to-DataFrame operators on click events."""
