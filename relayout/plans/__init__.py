"""Plan-level choices and checks: how rows are spread before a partitioned write
(``distribution``) and reading physical plans for assertions (``explain``)."""
