from .columns import *  # noqa: F401,F403
from .udfs import base_id_arrow  # noqa: F401
