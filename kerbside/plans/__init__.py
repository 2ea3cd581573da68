"""The jobs: transforms, the crash model and its views, loads and reports."""
