"""Launcher for spark-submit: ``spark-submit --py-files clickpanes.zip run_job.py <job> ...``."""

from clickpanes.cli import run

if __name__ == "__main__":
    run()
