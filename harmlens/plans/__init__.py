"""Named queries; importing this package fills the registry."""
from harmlens.plans import q_advisors, q_aggregates, q_graph, q_harmonize, q_sectors, q_storage, q_windows  # noqa: F401
from harmlens.plans.registry import REGISTRY  # noqa: F401
