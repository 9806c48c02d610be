"""Runs one study: spark-submit --py-files yearpanel.zip study.py STUDY --out DIR ..."""

from yearpanel.jobs import main

if __name__ == "__main__":
    main()
