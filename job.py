"""Entry script for spark-submit: ``spark-submit --py-files streakline.zip job.py --input ... --output ... --bad ...``.

Same flags as ``python -m streakline`` (see ``streakline/__main__.py``).
"""

from streakline.__main__ import main

if __name__ == "__main__":
    main()
