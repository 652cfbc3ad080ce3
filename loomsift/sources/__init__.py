"""File listings and readers."""
