import sys

from pagetrail.cli import main

main(sys.argv[1:])
