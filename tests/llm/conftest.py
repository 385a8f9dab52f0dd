import os
import sys
from pathlib import Path

HERE = Path(__file__).resolve().parent
sys.path.insert(0, str(HERE))
# Python workers import the package too.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [str(HERE.parent.parent), os.environ.get("PYTHONPATH", "")]))
