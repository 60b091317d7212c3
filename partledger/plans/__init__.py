"""The layers, each a set of DataFrame → DataFrame functions."""
