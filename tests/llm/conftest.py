import importlib.util
import sys
from pathlib import Path

_spec = importlib.util.spec_from_file_location("tests_llm_helpers", Path(__file__).with_name("helpers.py"))
sys.path.insert(0, str(Path(__file__).parent))
sys.modules["tests_llm_helpers"] = _module = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(_module)
