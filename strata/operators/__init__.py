"""DataFrame -> DataFrame operators.  None of them collects data to the
driver except where the result is bounded by a parameter (k centres, a
fixed bin count), and then only that bounded result."""
