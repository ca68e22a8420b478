"""Views, reports and data-quality checks as DataFrame functions."""
