"""spark-submit entry point for the command-line jobs (see plume/app.py).

    zip -r plume.zip plume
    spark-submit --py-files plume.zip launch.py stream --source kafka:broker:9092/posts \
        --out s3a://bucket/lake --checkpoint s3a://bucket/ckpt --bronze --partition-by-day
"""

import sys

from plume.app import main

if __name__ == "__main__":
    sys.exit(main())
