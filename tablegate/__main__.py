"""``python -m tablegate ...`` runs the audit job's command line (see ``tablegate.plans.job.main``)."""

from tablegate.plans.job import main

raise SystemExit(main())
