"""Launcher for spark-submit: ``spark-submit [--py-files propgraph.zip] propgraph_cli.py build ...``."""

from propgraph.__main__ import main

if __name__ == "__main__":
    main()
