"""DataFrame-to-DataFrame operators: shape, filter, join, aggregate, revise, write, check, log."""
