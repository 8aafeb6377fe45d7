"""``python -m scorewright --config job.yaml``: run a scoring job."""

from .plans.job import main

raise SystemExit(main())
