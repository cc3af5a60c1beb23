"""DataFrame-in / DataFrame-out operators."""
