#!/usr/bin/env python
"""Launcher for ``spark-submit``: ``spark-submit segmint_submit.py transform …``.

The NFKD UDF ships its code with each task, so executors need no installed
copy of the package; the driver finds it next to this file.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from segmint.cli import main  # noqa: E402

if __name__ == "__main__":
    sys.exit(main())
