"""Starts the command-line jobs: `spark-submit run_job.py JOB ...` or `python run_job.py JOB ...`."""

from tallyrate.jobs import main

if __name__ == "__main__":
    main()
