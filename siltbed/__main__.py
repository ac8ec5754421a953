import sys

from siltbed.plans.loader import main

sys.exit(main())
