"""Views and jobs composed from the operators."""
