import sys

from brindle.cli import main

sys.exit(main())
