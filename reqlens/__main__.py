import sys

from reqlens.cli import main

sys.exit(main())
