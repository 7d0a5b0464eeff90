"""``python -m regstat --sources ROOT --out DIR``: the whole run (see
``regstat.plans.run.main``)."""

from regstat.plans.run import main

raise SystemExit(main())
