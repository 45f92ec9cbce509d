"""The market jobs as file streams."""
