"""wavetide: seismic event-pair analytics and record hygiene as Spark jobs."""

import os

# Spark's tasks use the cores: one thread of linear algebra for each Python process. It counts where NumPy is loaded after this.
for _name in ("OPENBLAS_NUM_THREADS", "MKL_NUM_THREADS", "OMP_NUM_THREADS"):
    os.environ.setdefault(_name, "1")

__version__ = "0.2.0"
