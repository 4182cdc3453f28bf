"""Entry script of the jobs for spark-submit: ``spark-submit run_job.py curate cleaned/ curated/``."""

from reviewcraft.plans.jobs import main

if __name__ == "__main__":
    main()
