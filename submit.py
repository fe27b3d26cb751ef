"""spark-submit launcher for the end-to-end jobs.

    spark-submit --py-files quarry.zip submit.py sort <input_dir> <output_dir>
    spark-submit --py-files quarry.zip submit.py pagerank <input> <output_dir> [--rounds 10] [--format csv|text]

(``quarry.zip`` is the ``quarry/`` package zipped; locally ``python submit.py ...`` works as is.)
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.jobs import main  # noqa: E402

if __name__ == "__main__":
    sys.exit(main())
