"""Licence phrases and notices that scans look for, as plain words."""

# Phrases whose every place is counted, with their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Notices by label. A label may have several.
NOTICES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files, to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation",
    ),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by"),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    (
        "cc-by-notice",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain",
    ),
]
