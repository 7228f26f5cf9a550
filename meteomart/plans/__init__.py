"""Plan-level helpers: join strategy checks, materialisation, the pipeline."""
