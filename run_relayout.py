"""Launcher for spark-submit: ``spark-submit --py-files relayout.zip run_relayout.py --source ... --target ...``."""

from relayout.__main__ import main

if __name__ == "__main__":
    raise SystemExit(main())
