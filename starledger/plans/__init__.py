"""Space-object contracts and the jobs built from the operators."""
