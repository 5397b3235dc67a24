"""Python workers import the package from the repository, wherever pytest was started."""

import os
from pathlib import Path

ROOT = str(Path(__file__).resolve().parent.parent.parent)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])
