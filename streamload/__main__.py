"""``python -m streamload --config job.json``: run one configured stream (see :mod:`streamload.app`)."""

import sys

from streamload.app import main

sys.exit(main())
