"""spark-submit entry; see subtally/job.py for the steps."""

from subtally.job import main

if __name__ == "__main__":
    raise SystemExit(main())
