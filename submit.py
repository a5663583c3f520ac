"""spark-submit entry: ``spark-submit --py-files meteoframe.zip submit.py stream ...``."""

import sys

from meteoframe.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
