"""Entry script for spark-submit."""

from dailyfacts.cli import main

if __name__ == "__main__":
    main()
