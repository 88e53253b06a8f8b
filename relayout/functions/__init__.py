"""Column-expression helpers: equality predicate sets (``equalities``, ``Expr``), whole-name regex
matching and case folding, and expiry of keyed entries (``live``, ``expiry``)."""
