"""Tables a dashboard reads, and the run that produces them."""
