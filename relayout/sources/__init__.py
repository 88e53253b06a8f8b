"""Tables: catalog names or partitioned path tables (``PathTable``), their layouts, scans
(``read_table``, narrowed to the partition sub-folder the predicates fix), and writing new tables
(``write_table``, ``materialize``)."""
