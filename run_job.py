"""spark-submit entry point; see ``orrery/plans/cli.py``."""

from orrery.plans.cli import main

if __name__ == "__main__":
    main()
