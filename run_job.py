"""spark-submit entry point: ``spark-submit --py-files linkloom.zip run_job.py <job> ...``."""

import sys

from linkloom.jobs import main

if __name__ == "__main__":
    main(sys.argv[1:])
