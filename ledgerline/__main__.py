import sys

from ledgerline.cli import main

main(sys.argv[1:])
