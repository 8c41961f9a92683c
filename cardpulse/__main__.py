"""``python -m cardpulse stream|publish ...`` (see ``cardpulse.cli``)."""

from .cli import main

main()
