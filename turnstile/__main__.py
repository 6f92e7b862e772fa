import sys

from turnstile.cli import main

sys.exit(main())
