"""The phrases and notices that the license scan looks for."""

# The base phrases, each found exactly, as (label, phrase).
BASE_PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

# The wording of well-known public licenses' notices, found by likeness, as (label, wording).
NOTICES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the Software"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "licensed under the BSD license"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies"),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License"),
    ("apache-2", "licensed under the Apache License, Version 2.0"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("gpl", "licensed under the GNU General Public License"),
    ("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("lgpl", "licensed under the GNU Lesser General Public License"),
    ("agpl", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("agpl", "licensed under the GNU Affero General Public License"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("mpl-2", "licensed under the Mozilla Public License, Version 2.0"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "licensed under CC BY 4.0"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-sa", "licensed under CC BY-SA 4.0"),
    ("cc-by-nd", "licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    ("cc-by-nd", "licensed under CC BY-ND 4.0"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc", "licensed under CC BY-NC 4.0"),
    ("cc-by-nc-sa", "licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    ("cc-by-nc-sa", "licensed under CC BY-NC-SA 4.0"),
    ("cc0", "the person who associated CC0 with this work has waived all copyright and related or neighboring rights to this work"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)
