"""Start a batch job: ``spark-submit run.py <job> --root ... --batch-date ...``."""

from siltstone.plans.jobs import main

if __name__ == "__main__":
    main()
