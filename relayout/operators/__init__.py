"""The operators: the relayout job (``job``), schema containment (``containment``), table
descriptors (``descriptors``), table names (``names``) and keyed lookup with expiry (``lookup``)."""
