import importlib.util
import pathlib

_spec = importlib.util.spec_from_file_location("llm_brute", pathlib.Path(__file__).with_name("brute.py"))
brute = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(brute)
