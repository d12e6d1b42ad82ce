"""Small landing documents."""

import json
import os


def feature(fid, coordinates=(1.5, 2.5, 3.5), geometry=True, **properties):
    return {
        "type": "Feature",
        "properties": properties,
        "geometry": {"type": "Point", "coordinates": list(coordinates)} if geometry else None,
        "id": fid,
    }


def collection(*features):
    return {
        "type": "FeatureCollection",
        "metadata": {"generated": 1700000000000, "title": "test", "status": 200, "count": len(features)},
        "features": list(features),
    }


def land(path, *documents, name="part.json", indent=None):
    """Write documents as a landing file, one per line unless indented."""
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as out:
        out.write("\n".join(json.dumps(d, indent=indent) for d in documents) + "\n")
    return str(path)
