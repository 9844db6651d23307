"""Work-history analytics as plain DataFrame-to-DataFrame functions."""
