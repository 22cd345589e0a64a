"""``spark-submit run_job.py <job> ...``; see tickforge/plans/jobs.py."""

from tickforge.plans.jobs import main

if __name__ == "__main__":
    main()
