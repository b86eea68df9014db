"""Analytics over public statistics published as long-form observations."""
